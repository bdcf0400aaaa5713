"""Column functions over printed figures, dates of fiscal calendars, and labels and names. All are native expressions unless said."""
