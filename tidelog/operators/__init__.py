"""DataFrame operators: frame in, frame out, nothing executed beyond a bounded key sample."""
