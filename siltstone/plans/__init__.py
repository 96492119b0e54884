"""The layers: silver, gold marts, panels, checks, publishing."""
