"""Regional energy, transport and emissions statistics as Spark DataFrame code."""
