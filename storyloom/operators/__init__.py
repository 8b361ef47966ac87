"""DataFrame -> DataFrame operators; each works on batch and streaming frames
unless its docstring says otherwise."""
