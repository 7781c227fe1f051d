"""ledgerflow: multi-source sales analytics on Spark."""
