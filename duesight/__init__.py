"""Receivables ageing as Spark jobs: open items, month buckets, summaries, outbox."""
