"""Analytics plans (P&L, emission mart, booking listing) and the fixture mapping."""
