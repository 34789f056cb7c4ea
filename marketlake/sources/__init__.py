"""Sources and sinks: proxy views over the test tables, JSONL landing and
scanning, the per-event parquet cache and keyed / keyless table writes."""
