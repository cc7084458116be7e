"""DataFrame operators: validation, trailing windows, rules, alerts, profiles."""
