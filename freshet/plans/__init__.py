"""Job plans (renewal, weather status) and the registered query catalog."""
