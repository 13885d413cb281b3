"""Errors raised for invalid configuration or data that breaks an operator's rules."""


class ConfigError(ValueError):
    """The options of an operator contradict each other or the tables."""


class SchemaChangeError(ConfigError):
    """Source and target schemas differ in a way the chosen mode forbids."""


class ContractError(ConfigError):
    """A DataFrame does not have the declared columns or types."""
