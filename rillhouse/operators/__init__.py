"""DataFrame -> DataFrame building blocks, the same for static and streaming input unless said otherwise."""
