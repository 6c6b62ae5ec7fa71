"""DataFrame operators: query, key comparison, edits, results, attachments."""
