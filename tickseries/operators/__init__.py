"""DataFrame -> DataFrame operators. They are lazy unless their text says otherwise."""
