"""Jobs and chains composed of sources, operators and sinks."""
