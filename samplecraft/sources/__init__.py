"""Where datasets come from and go to."""
