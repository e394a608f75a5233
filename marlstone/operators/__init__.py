"""DataFrame to DataFrame operators: keys, columns, rules and dates are parameters."""
