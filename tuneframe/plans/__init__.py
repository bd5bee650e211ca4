"""Plans that combine operators, and the skew-safe building blocks they share."""
