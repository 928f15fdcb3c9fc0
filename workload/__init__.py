"""The registered queries: every operator run over the driver tables."""
