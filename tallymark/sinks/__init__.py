"""Writers of exports and logs."""
