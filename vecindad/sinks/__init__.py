"""Writers for tables and XML documents."""
