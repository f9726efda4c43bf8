"""DataFrame-to-DataFrame operators over a panel."""
