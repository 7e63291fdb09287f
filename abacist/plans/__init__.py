"""The operators bound to the generated test tables, with one SQL twin each."""
