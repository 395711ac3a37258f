"""Column-level building blocks (JSON, money, currency, cards, timestamps)."""
