"""Jobs: each ``plan`` builds the frames, each ``run`` also writes them."""
