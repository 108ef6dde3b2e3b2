"""Operations and security data jobs expressed as Spark DataFrame operators."""
