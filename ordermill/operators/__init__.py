"""DataFrame-to-DataFrame operators for ingest, bronze, carts and the shop."""
