"""Column-in / Column-out building blocks; no actions, no joins."""
