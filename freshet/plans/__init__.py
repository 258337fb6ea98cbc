"""One function per warehouse job."""
