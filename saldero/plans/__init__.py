"""Jobs, marts, measures and reports composed from the operators."""
