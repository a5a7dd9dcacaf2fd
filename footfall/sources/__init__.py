"""Where rows come from. Readers return DataFrames; nothing is read on the driver."""
