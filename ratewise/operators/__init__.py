"""Functions from DataFrame to DataFrame. Window operators and event parsing
take streams as well. Only bounded rows reach the driver: levels of seen
items, buckets of a micro-batch, the popular list, model scores."""
