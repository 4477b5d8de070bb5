"""Where rows come from: raw tables, the calendar, and stand-in raw tables."""
