"""Running the batch checks on layers that arrive as a stream of loads."""
