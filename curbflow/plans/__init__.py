"""The jobs: trip creation, lifting, sweeping, roll-up, service log, repair, and one batch of them."""
