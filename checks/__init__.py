"""Every operator run over the driver tables, each with an independent SQL statement."""
