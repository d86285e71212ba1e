"""DataFrame-in / DataFrame-out product-analytics operators."""
