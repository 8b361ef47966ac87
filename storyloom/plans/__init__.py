"""Job plans: the batch digest job and the registered queries."""
