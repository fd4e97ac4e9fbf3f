"""The domain jobs. Every function takes and returns DataFrames; nothing is shared behind the scenes."""
