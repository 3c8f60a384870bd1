"""Multi-step work built from the operators: preparing stages, back-tests, training runs, scoring."""
