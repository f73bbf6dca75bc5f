"""feeloom: fee-ledger analytics (staging, lifetime value, attribution, checks) as Spark DataFrame jobs."""
