"""DataFrame operators. Each returns a lazy ``DataFrame``; none collects rows to the driver."""
