"""Test reports in, validated and resolved measurements out, as DataFrame operators."""
