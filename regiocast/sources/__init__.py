from regiocast.sources.tables import Tables, first_usable, with_standard_names

__all__ = ["Tables", "first_usable", "with_standard_names"]
