"""Sources and sinks: XML bulletins, JSON layouts, warehouse tables."""
