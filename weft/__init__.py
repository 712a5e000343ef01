"""weft: episode, table and text analytics on the DataFrame API."""
