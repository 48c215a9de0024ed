"""Part of the terrain engine; see the README."""
