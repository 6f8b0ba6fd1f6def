"""postledger: a Spark warehouse for listings that are scraped again and again."""
