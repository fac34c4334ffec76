"""Generic DataFrame operators; none of them knows the rental domain."""
