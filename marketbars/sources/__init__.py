"""Readers: landed payloads, symbol masters, ledgers, bar tables, dimensions."""
