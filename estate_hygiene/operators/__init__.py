"""DataFrame-to-DataFrame operators. All are lazy and free of side effects."""
