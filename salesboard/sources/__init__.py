"""Raw inputs: topic / file-stream readers, offsets, table-derived fixtures."""
