"""Where results go: one replaceable folder per micro-batch."""
