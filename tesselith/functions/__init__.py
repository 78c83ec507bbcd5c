"""Part of tesselith."""
