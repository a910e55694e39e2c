"""epitide: surveillance-panel analytics written as Spark DataFrame transformations."""
