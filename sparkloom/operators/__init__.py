"""DataFrame operators: tables in, tables out, lazy unless a docstring says otherwise."""
