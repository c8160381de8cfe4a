"""Generic DataFrame operators; every one takes the column names it works on."""
