"""Reading raw and staged tables, checking inputs, writing results."""
