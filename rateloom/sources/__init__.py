"""Feed parsers over landed responses, response fetching, files and tables."""
