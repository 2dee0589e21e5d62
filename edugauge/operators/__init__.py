"""Table operators: ``DataFrame -> DataFrame``, lazy, without Python functions on rows."""
