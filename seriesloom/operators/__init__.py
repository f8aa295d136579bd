"""DataFrame-to-DataFrame operators and distributed model fits."""
