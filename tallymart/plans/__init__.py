"""Tables, metrics and questions composed from the operators."""
