"""Writers of result tables and small documents."""
