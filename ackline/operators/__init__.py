"""DataFrame -> DataFrame operators over record, delivery, completion and transfer logs."""
