"""Part of forelight; see README.md."""
