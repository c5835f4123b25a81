"""Column functions over titles, links and wikitext."""
