"""Pure DataFrame -> DataFrame operators of the lake layers."""
