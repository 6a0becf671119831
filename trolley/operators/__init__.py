"""Operator families; every public function maps DataFrame(s) to a DataFrame."""
