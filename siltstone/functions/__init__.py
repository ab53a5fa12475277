"""Part of siltstone; see the README."""
