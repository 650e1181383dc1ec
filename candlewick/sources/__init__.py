"""Reading and writing: messages, the partitioned tick log, keyed tables, scratch space."""
