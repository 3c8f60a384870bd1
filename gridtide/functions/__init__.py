"""Column functions: calendar arithmetic on zone-less timestamps and date parts."""
