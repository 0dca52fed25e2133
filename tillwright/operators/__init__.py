"""DataFrame -> DataFrame operators; the same code serves batch and streams."""
