"""DataFrame -> DataFrame operators, one module per step of the invoice flow."""
