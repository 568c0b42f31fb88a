"""Tables, files and message logs: readers, writers and their upkeep."""
