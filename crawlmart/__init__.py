"""crawlmart: fetched web responses in, an article star schema out, on PySpark."""
