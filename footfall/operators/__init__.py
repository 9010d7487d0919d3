"""DataFrame operators: lazy, without actions of their own."""
