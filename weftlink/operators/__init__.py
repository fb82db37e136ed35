"""DataFrame operators: blocking, features, scoring, assignment, evaluation."""
