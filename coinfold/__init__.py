"""coinfold: unspent-output ledger processing as Spark DataFrame jobs."""
