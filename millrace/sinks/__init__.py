"""Writers and read-back checks."""
