"""Column expressions: text, classifiers, adapters, token estimates."""
