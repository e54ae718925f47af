"""Column expressions: exact KPI ratios and lift, calendar-day helpers."""
