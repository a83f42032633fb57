"""Writers for delimited output, typed tables, count reports and audit rows."""
