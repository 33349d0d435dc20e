"""Column functions: calendars, text, rules and rates."""
