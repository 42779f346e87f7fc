"""Writers: run sheets, metadata, sample indexes, queue, snapshots, packages, publishing."""
