"""Column functions: dates, money and business rules."""
