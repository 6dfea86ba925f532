"""Column builders: quarterly periods and the scalar functions of equations."""
