"""Column builders: dates, HHMM clocks, delays."""
