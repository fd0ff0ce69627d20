"""Sources and sinks: testdata tables, domain bindings, result files, writers."""
