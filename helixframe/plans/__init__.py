"""Reports, imports and exports composed from the operators."""
