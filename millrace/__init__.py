"""Supply-chain analytics on Spark: bronze orders to silver, ledger, inventory and gold KPIs."""
