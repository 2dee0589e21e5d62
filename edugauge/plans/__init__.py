"""The layers and the analyses composed from the operators."""
