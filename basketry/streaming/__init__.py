"""The layers as triggered streaming queries: read what is new, then stop."""
