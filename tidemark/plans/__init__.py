"""The flows: whole jobs put together from the operators."""
