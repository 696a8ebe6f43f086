"""Writers: immutable staging, partition replacement, full rebuilds."""
