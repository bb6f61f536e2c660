"""DataFrame -> DataFrame operators; all of them are lazy unless they say otherwise."""
