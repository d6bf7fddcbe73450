"""Exceptions raised by the gates.  Each gate also returns its findings as a
DataFrame, so a caller may inspect instead of raising."""


class StrataError(Exception):
    """Base class of every gate error."""


class SourceError(StrataError):
    """A source file or raw dataset is missing, empty or inconsistent."""


class PaymentValidationError(StrataError, ValueError):
    """Negative payment values were found."""


class SchemaValidationError(StrataError):
    """A dataset's structure does not match its rule schema."""


class QualityCheckError(StrataError):
    """Primary-key duplicates or null rates over their limit."""


class DeduplicationError(StrataError):
    """Duplicates exist and no tiebreaker says which row to keep."""


class ReconciliationError(StrataError):
    """Orders whose payments do not match their items within tolerance."""


class AnalyticsValidationError(StrataError):
    """Analytics outputs fail GMV reconciliation or have null key values."""
