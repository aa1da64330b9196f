"""Column expressions: everything here returns a native ``Column`` unless named ``*_udf``."""
