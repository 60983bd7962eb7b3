"""Jobs to run by hand or by a timer; each has a command line and a small configuration."""
