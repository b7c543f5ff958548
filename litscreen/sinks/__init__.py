"""Writers: every one of them may be run again after a failure without changing the result."""
