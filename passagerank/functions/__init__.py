"""Column-level building blocks: text analysis, stemming, term weights."""
