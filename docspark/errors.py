"""Errors raised by docspark jobs."""


class DocSparkError(Exception):
    """Base class."""


class SchemaError(DocSparkError):
    """A collection declaration is invalid (no fields, bad type, bad option)."""


class BulkPartialFailureError(DocSparkError):
    """Some documents of a bulk write were rejected and the caller asked to fail."""

    def __init__(self, message: str, result=None):
        super().__init__(message)
        self.result = result


class BreakingChangeError(DocSparkError):
    """An additive evolution was refused because existing fields changed."""

    def __init__(self, message: str, changed_fields=()):
        super().__init__(message)
        self.changed_fields = list(changed_fields)


class MigrationError(DocSparkError):
    """A versioned rebuild failed; the logical name still points at the old version."""


class CollectionNotFoundError(DocSparkError):
    """No table or view exists under the given name."""


class FieldLimitError(DocSparkError):
    """A write would bring more different fields than a collection may get."""
