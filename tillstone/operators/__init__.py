"""DataFrame-to-DataFrame steps of the retail flow."""
