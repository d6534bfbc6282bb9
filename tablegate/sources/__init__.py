"""Slices, manifests and the shared folder work files go to."""
