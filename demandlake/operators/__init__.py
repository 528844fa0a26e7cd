"""DataFrame -> DataFrame operators; nothing in here reads or writes storage."""
