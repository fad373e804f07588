"""Sources and sinks: tables, text lines, records, literals, HTML pages."""
