"""Sources: API fetch (transports, token bucket, retries), id lists, paging, files, staging, named REST source."""
